"""Small retail data sets with known results. All rows are fixed values."""

FOOD_CUSTOMERS = """\
customer_id,first_name,last_name,email,phone,address
1,Amit,Sharma,amit@gmail.com,9876543210,Delhi
2,Priya,Singh,priya@yahoo.com,9876541009,Mumbai
3,Rahul,Verma,rahul@gmail.com,8876540998,Bengaluru
4,Neha,Patel,neha@yahoo.com,7876540987,Ahmedabad
5,Arjun,Gupta,arjun@gmail.com,6876541234,Hyderabad
"""

FOOD_ITEMS = """\
food_id,name,price,category,availability
1,Paneer Butter Masala,250,Main Course,Available
2,Chicken Biryani,300,Main Course,Available
3,Masala Dosa,120,Breakfast,Available
4,Samosa,30,Snacks,Available
5,Gulab Jamun,50,Dessert,Available"""

FOOD_ORDERS = """\
order_id,customer_id,food_id,quantity,order_date,status,total_amount
1,1,2,2,2026-07-10 12:30:00,Delivered,600
2,2,1,1,2026-07-11 13:15:00,Delivered,250
3,3,3,3,2026-07-11 09:00:00,Delivered,360
4,4,4,5,2026-07-12 17:45:00,Delivered,150
5,5,5,4,2026-07-12 21:00:00,Delivered,200
6,1,1,1,2026-07-13 14:00:00,Delivered,250
7,2,2,2,2026-07-13 20:30:00,Delivered,600
8,3,5,2,2026-07-14 19:15:00,Delivered,100
9,4,3,2,2026-07-15 08:30:00,Delivered,240
10,5,2,1,2026-07-15 13:00:00,Delivered,300
11,1,4,10,2026-07-16 18:00:00,Delivered,300
12,2,3,1,2026-07-17 09:30:00,Preparing,120"""

SHOP_CUSTOMERS = """\
customer_id,customer_name,city,membership
1,Amit,Hyderabad,Gold
2,Priya,Bengaluru,Silver
3,Rahul,Chennai,Gold
4,Neha,Pune,Silver
5,Arjun,Delhi,Platinum
"""

SHOP_PRODUCTS = """\
product_id,product_name,category,price
101,Laptop,Electronics,60000
102,Mobile,Electronics,25000
103,Headphones,Accessories,3000
104,Keyboard,Accessories,1500
105,Monitor,Electronics,12000
"""

SHOP_SALES = """\
sale_id,customer_id,product_id,branch_id,quantity,sale_date,total_amount
1,1,101,1,1,2026-07-01,60000
2,2,102,2,2,2026-07-02,50000
3,3,103,2,3,2026-07-03,9000
4,4,104,1,5,2026-07-04,7500
5,5,105,3,2,2026-07-05,24000
6,1,102,1,1,2026-07-06,25000
7,2,105,2,1,2026-07-07,12000
8,3,101,3,1,2026-07-08,60000
9,4,103,1,2,2026-07-09,6000
10,5,102,3,1,2026-07-10,25000
11,1,104,1,4,2026-07-11,6000
12,2,103,2,2,2026-07-12,6000
"""

SALES_HISTORY = """\
sale_id,customer_id,product_id,branch_id,quantity,sale_date,total_amount
1,1,101,1,1,2026-07-01,60000
2,2,102,2,2,2026-07-02,50000
3,3,103,2,2,2026-07-03,3000
4,4,104,1,5,2026-07-04,4000
5,5,105,3,2,2026-07-05,24000
"""

NEW_SALES = """\
sale_id,customer_id,product_id,branch_id,quantity,sale_date,total_amount
6,1,102,1,1,2026-07-06,25000
7,2,105,2,1,2026-07-07,12000
8,3,101,3,1,2026-07-08,60000
9,4,103,1,2,2026-07-09,3000
10,5,102,3,1,2026-07-10,25000
"""

STAR_CUSTOMERS = """\
customer_id,customer_name,city,state,membership
1,Amit Sharma,Hyderabad,Telangana,Gold
2,Priya Singh,Bangalore,Karnataka,Silver
3,Rahul Verma,Chennai,Tamil Nadu,Gold
4,Neha Patel,Ahmedabad,Gujarat,Silver
5,Arjun Gupta,Delhi,Delhi,Platinum
6,Kiran Kumar,Vijayawada,Andhra Pradesh,Gold
7,Suresh Reddy,Warangal,Telangana,Silver
8,Pooja Mehta,Mumbai,Maharashtra,Gold
9,Rohit Jain,Jaipur,Rajasthan,Silver
10,Divya Nair,Kochi,Kerala,Gold
11,Mohan Rao,Visakhapatnam,Andhra Pradesh,Silver
12,Anjali Das,Kolkata,West Bengal,Gold
13,Naveen Yadav,Lucknow,Uttar Pradesh,Silver
14,Sneha Iyer,Coimbatore,Tamil Nadu,Gold
15,Rakesh Mishra,Patna,Bihar,Platinum
16,Kavya Rani,Bhopal,Madhya Pradesh,Silver
17,Varun Kapoor,Chandigarh,Chandigarh,Gold
18,Swathi Rao,Mysore,Karnataka,Silver
19,Nikhil Joshi,Nagpur,Maharashtra,Gold
20,Meera Thomas,Thiruvananthapuram,Kerala,Platinum
"""

STAR_PRODUCTS = """\
product_id,product_name,category,brand,price
101,Laptop,Electronics,Dell,65000
102,Smartphone,Electronics,Samsung,28000
103,Tablet,Electronics,Apple,45000
104,Monitor,Electronics,LG,18000
105,Smart Watch,Electronics,Apple,22000
106,Keyboard,Accessories,Logitech,1800
107,Mouse,Accessories,HP,900
108,Headphones,Accessories,Sony,3500
109,Speaker,Accessories,JBL,5500
110,Web Camera,Accessories,Logitech,4200
111,Printer,Office Equipment,HP,15000
112,Scanner,Office Equipment,Canon,12000
113,Projector,Office Equipment,Epson,48000
114,Router,Networking,TP-Link,3200
115,Network Switch,Networking,Cisco,12500
116,External SSD,Storage,Samsung,9500
117,Hard Disk,Storage,Seagate,6500
118,USB Pen Drive,Storage,SanDisk,1200
119,Power Bank,Mobile Accessories,Mi,1800
120,Wireless Charger,Mobile Accessories,Anker,2500
"""

STAR_BRANCHES = """\
branch_id,branch_name,city,state,region,manager_name
1,Hyderabad Central,Hyderabad,Telangana,South,Rajesh Kumar
2,Bangalore Tech Park,Bangalore,Karnataka,South,Priya Nair
3,Chennai City Mall,Chennai,Tamil Nadu,South,Suresh Reddy
4,Mumbai Business Hub,Mumbai,Maharashtra,West,Anita Sharma
5,Delhi Connaught Place,Delhi,Delhi,North,Rahul Verma
6,Ahmedabad Plaza,Ahmedabad,Gujarat,West,Kiran Patel
7,Kolkata City Center,Kolkata,West Bengal,East,Subhash Das
8,Jaipur Pink Square,Jaipur,Rajasthan,North,Neha Gupta
9,Kochi Metro Mall,Kochi,Kerala,South,Arun Thomas
10,Lucknow Galleria,Lucknow,Uttar Pradesh,North,Vivek Mishra
"""

CUSTOMER_STATE = """\
customer_id,customer_name,city,state,membership,segment
101,Amit Sharma,Hyderabad,Telangana,Silver,Regular
102,Priya Reddy,Warangal,Telangana,Gold,Premium
103,Rahul Verma,Vijayawada,Andhra Pradesh,Silver,Regular
104,Neha Patel,Hyderabad,Telangana,Gold,Premium
105,Arjun Gupta,Nagpur,Maharashtra,Bronze,Regular"""

CUSTOMER_UPDATES = """\
customer_id,customer_name,city,state,membership,segment,effective_date
101,Amit Sharma,Bengaluru,Karnataka,Gold,Premium,2026-04-01
103,Rahul Verma,Chennai,Tamil Nadu,Gold,Premium,2026-04-05
104,Neha Patel,Hyderabad,Telangana,Platinum,Premium,2026-04-10"""


def star_sales() -> str:
    """100 sales by rule: every key cycles, the amount is price times quantity."""
    prices = [int(line.rsplit(",", 1)[1]) for line in STAR_PRODUCTS.splitlines()[1:]]
    lines = ["sale_id,customer_id,product_id,branch_id,date_id,quantity,total_amount"]
    for n in range(100):
        quantity = n % 5 + 1
        lines.append(f"{n + 1},{n % 20 + 1},{n % 20 + 101},{n % 10 + 1},{n % 31 + 1},{quantity},"
                     f"{prices[n % 20] * quantity}")
    return "\n".join(lines)


def put(folder, name: str, text: str) -> str:
    path = folder / name
    path.write_text(text)
    return str(path)
