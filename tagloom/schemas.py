"""Schemas as data: taxonomy, model registry, tag store, extract column lists."""

from __future__ import annotations

from pyspark.sql import types as T

TAXONOMY_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("rule", T.StringType()),
    T.StructField("level", T.IntegerType()),
    T.StructField("pid", T.LongType()),
    T.StructField("ctime", T.TimestampType()),
    T.StructField("utime", T.TimestampType()),
])

MODEL_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("tag_id", T.LongType()),
    T.StructField("model_name", T.StringType()),
    T.StructField("state", T.IntegerType()),  # 1..4; 3 = enabled, 4 = disabled
    T.StructField("model_path", T.StringType()),
    T.StructField("model_main", T.StringType()),
    T.StructField("sche_time", T.StringType()),
    T.StructField("args", T.StringType()),
    T.StructField("ctime", T.TimestampType()),
    T.StructField("utime", T.TimestampType()),
])

STORE_SCHEMA = T.StructType([
    T.StructField("userId", T.StringType()),
    T.StructField("tagsId", T.StringType()),
])

# Column lists of the four warehouse extracts, in file order.
# Field 0 is the row key.  Every field is a string.
LOGS_COLUMNS = """
id log_id remote_ip site_global_ticket site_global_session global_user_id
cookie_text user_agent ref_url loc_url log_time
""".split()
# 11 columns

USERS_COLUMNS = """
id siteid avatarimagefileid email username password salt registertime
lastlogintime lastloginip memberrankid bigcustomerid lastaddressid
lastpaymentcode gender birthday qq job mobile politicalface nationality
validatecode pwderrcount source marriage money moneypwd isemailverify
issmsverify smsverifycode emailverifycode verifysendcoupon canreceiveemail
modified channelid grade_id nick_name is_blacklist
""".split()
# 38 columns

ORDERS_COLUMNS = """
id siteid istest hassync isbackend isbook iscod notautoconfirm ispackage
packageid ordersn relationordersn memberid predictid memberemail addtime
synctime orderstatus paytime paymentstatus receiptconsignee receiptaddress
receiptzipcode receiptmobile productamount orderamount paidbalance
giftcardamount paidamount shippingamount totalesamount
usedcustomerbalanceamount customerid bestshippingtime paymentcode
paybankcode paymentname consignee originregionname originaddress province
city region street markbuilding poiid poiname regionname address zipcode
mobile phone receiptinfo delayshiptime remark bankcode agent confirmtime
firstconfirmtime firstconfirmperson finishtime tradesn signcode source
sourceordersn onedaylimit logisticsmanner aftersalemanner personmanner
visitremark visittime visitperson sellpeople sellpeoplemanner ordertype
hasreadtaobaoordercomment memberinvoiceid taobaogroupid tradetype
steptradestatus steppaidfee depositamount balanceamount autocanceldays
isnolimitstockorder ccborderreceivedlogid ip isgiftcardorder
giftcarddownloadpassword giftcardfindmobile autoconfirmnum codconfirmperson
codconfirmtime codconfirmremark codconfirmstate paymentnoticeurl addresslon
addresslat smconfirmstatus smconfirmtime smmanualtime smmanualremark
istogether isnotconfirm tailpaytime points modified channelid isproducedaily
couponcode couponcodevalue ckcode
""".split()
# 112 columns

GOODS_COLUMNS = """
id siteid istest hasread supportonedaylimit orderid cordersn isbook
cpaymentstatus cpaytime producttype productid productname sku price number
lockednumber unlockednumber productamount balanceamount couponamount
esamount giftcardnumberid usedgiftcardamount couponlogid activityprice
activityid cateid brandid netpointid shippingfee settlementstatus
receiptorrejecttime iswmssku scode tscode tsshippingtime status productsn
invoicenumber expressname invoiceexpressnumber postman postmanphone isnotice
noticetype noticeremark noticetime shippingtime lessordersn
waitgetlesshippinginfo getlesshippingcount outping lessshiptime closetime
isreceipt ismakereceipt receiptnum receiptaddtime makereceipttype
shippingmode lasttimeforshippingmode lasteditorforshippingmode systemremark
tongshuaiworkid orderpromotionid orderpromotionamount externalsalesettingid
recommendationid hassendalertnum isnolimitstockproduct hpregisterdate
hpfaildate hpfinishdate hpreservationdate shippingopporunity istimeoutfree
itemshareamount lessshiptintime lessshiptouttime cbsseccode points modified
splitflag splitrelatecordersn channelid activityid2 pdorderstatus omsordersn
couponcode couponcodevalue storeid storetype stocktype o2otype brokeragetype
ogcolor
""".split()
# 97 columns

EXTRACT_COLUMNS = {
    "logs": LOGS_COLUMNS,
    "users": USERS_COLUMNS,
    "orders": ORDERS_COLUMNS,
    "goods": GOODS_COLUMNS,
}

# Fixed value: the field separator of the extracts.
EXTRACT_SEP = "\x01"


def string_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])
